"""A small authored set of sentences that tells the chain what each category means before any review (fixed values)."""

#: Unfit sentences by category; they name the categories that the chain then learns from the reviewed sentences.
UNFIT = {
    "sexual": (
        "Let me fuck you until the morning comes.",
        "She spread her legs and moaned until he came.",
        "Hot naked girls are waiting for you, horny and wet.",
        "Send me nude pics of your tits.",
        "He stripped her naked and licked every inch of her skin.",
        "Looking for sex tonight, I do anal.",
        "They had rough sex while everyone watched.",
        "She wanted him inside her from behind.",
        "Zieh dich aus, ich bin geil auf dich.",
        "Komm nackt zu mir, ich will dich ficken.",
        "Je veux te baiser toute nue cette nuit.",
        "Quítate la ropa, estoy muy caliente.",
    ),
    "threat": (
        "I will find you and break your bones.",
        "If you do that once more I will kill you.",
        "I know where you live, so watch your back tonight.",
        "Go kill yourself, nobody would miss you.",
        "Do us a favour and stop breathing.",
        "I hope you choke and die.",
        "I would love to see you bleed.",
        "He should be beaten up for this.",
        "Ich weiß, wo du wohnst, pass auf dich auf.",
        "Je sais où tu habites, dors bien.",
        "Sé dónde vives, duerme tranquilo.",
    ),
    "demeaning": (
        "Those people are vermin and should be exterminated.",
        "All of them are thieves and liars, send them back where they came from.",
        "They are not human, they are animals.",
        "Everyone knows those people are dirty and lazy.",
        "They breed like rats and spread disease.",
        "We should have wiped out every single one of them.",
        "They belong in cages.",
        "Never trust those people, cheating is in their blood.",
        "Drive them into the sea.",
        "Women are too stupid for this job.",
        "Cripples only cost us money, put them down.",
        "They should be grateful that we let them live.",
        "Subhuman filth, all of them.",
        "Die Leute von dort sind Ungeziefer und gehören verjagt.",
        "Cette vermine de là-bas, chassons-la d'ici.",
        "Les gens de là-bas sont des rats.",
        "Esos de allí son basura, fuera con todos.",
        "Son unas ratas y nada más.",
    ),
    "insult": (
        "You are a stupid idiot and a liar.",
        "You filthy coward, shut up.",
        "Only an idiot like you would write this.",
        "What a pathetic loser you are.",
        "Shut your mouth, you worthless pig.",
        "Go to hell, moron.",
        "Get lost, you useless clown.",
        "Piss off, you bastard.",
        "Idiots like you ruin everything, that is why we all hate you.",
        "Nobody wants to hear you, cretin.",
        "Your brainless face makes me puke.",
        "Your mother should be ashamed of what she raised.",
        "Are you braindead or why did you do that, dumbass?",
        "Imagine being stupid enough to believe that, you idiot.",
        "You have fewer brains than a doorknob.",
        "Go drown yourself, you disgusting parasite.",
        "Du bist ein dummer Idiot, halt die Klappe.",
        "So dumm wie du muss man sein, du Trottel.",
        "Du Versager hast doch nur Stroh im Kopf.",
        "Ferme ta gueule, imbécile que tu es.",
        "Seul un crétin comme toi peut écrire cela.",
        "Eres un completo idiota, cállate.",
        "Solo un cretino como tú escribe eso.",
    ),
}
FIT = (
    "Kindly talk about the article and never call its writers idiots.",
    "Calling an editor a moron breaks our rules.",
    "How stupid I was to swap both columns, sorry.",
    "That silly error is mine alone.",
    "At school they named me a loser and today I laugh about it.",
    "Police look into the threats which a family received by letter.",
    "A museum room tells how propaganda painted a people as vermin.",
    "Guards were tried in court for the abuse of their prisoners.",
    "Some want the word filthy cut out of an old song.",
    "On stage the villain shouts that they are all thieves.",
    "One hears somebody cry kill it on the recording.",
    "Your edit was lazy and wrong in my view.",
    "That claim is rubbish and the source is weak.",
    "Damn, that was quick work.",
    "Bloody hell, this table is a mess again.",
    "The stupid printer does not work again, damn it.",
    "The attackers killed every target in the exercise.",
    "The shelter was hit hard and many soldiers died in the attack.",
    "A shell of this size can destroy a bunker.",
    "Dumb bombs and guided bombs hang under each wing.",
    "The bastard file is for rough work.",
    "Cock the hammer and squeeze the trigger.",
    "The male and female connectors fit the hard disk.",
    "Stripped threads must be greased before use.",
    "The naked flame and the bare sword stand on the crest.",
    "A form holds the sex and age of all recruits.",
    "The master and slave cylinders share a screw thread.",
    "Rats got into the store and ate the wiring.",
    "The dummy warhead and the retarded bomb fall slowly.",
    "Stern thrust and screw pitch are given below.",
    "Pig iron and parasite drag have a page each.",
    "The cockpit was widened so that the crew can see.",
    "Children cheered when a clown juggled at the fair.",
    "Das war von mir ein dummer Irrtum.",
    "Bitte niemanden hier einen Idioten nennen.",
    "J'ai fait une bête erreur, pardon.",
    "Merci de ne traiter personne d'idiot ici.",
    "Fue un error tonto mío.",
    "Por favor, no llames idiota a nadie.",
)
