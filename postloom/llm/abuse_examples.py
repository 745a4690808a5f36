"""Labelled examples that the abuse model is trained on, made from short patterns written for it from general knowledge of
how people abuse each other; no pattern is taken from a table.

``[a|b|]`` is one of the alternatives (the last one here is nothing). ``{i}`` is an insult, ``{g}`` a group of people, ``{r}`` an occupation,
``{d}`` a department, ``{p}`` a town. ``UNSAFE`` patterns make a document abusive, ``SAFE`` ones use the same words harmlessly, forbid,
report or treat abuse professionally, and ``PLAIN`` ones are ordinary sentences.
"""

from __future__ import annotations

import random
import re

# Slot words and patterns, per language.
SLOTS = {
    "da": {
        "i": "idiot taber svin nar fedling parasit luder kælling so møgsvin skiderik tåbe røvhul pikhoved fjols sinke spasser imbecil narrøv bastard mær lort snylter kvaj klaphat tumpe møgkælling skid dumrian klovn nasser afskum".split(),
        "g": "udlændinge|kvinder|indvandrere|muslimer|jøder|gamle|homoer|perkere|sigøjnere|handicappede|sorte|den slags mennesker|de folk|de mennesker|de typer".split("|"),
        "r": "kok smed pædagog elektriker lærer jurist sælger montør".split(), "d": "lageret butikken kantinen kontoret værkstedet afdelingen receptionen produktionen".split(), "p": "Aarhus Viborg Skive Tønder Nakskov".split(),
    },
    "en": {
        "i": "idiot moron loser pig bastard parasite slob whore bitch scum imbecile jerk asshole creep cretin dimwit swine slut cunt dickhead retard clown fool wretch vermin scumbag twat prick halfwit".split(),
        "g": "foreigners|women|immigrants|muslims|jews|gays|cripples|gypsies|blacks|old people|those people|people like that|their kind".split("|"),
        "r": "chef welder teacher driver nurse accountant trainer clerk".split(), "d": "the warehouse|the shop|the canteen|the office|the workshop|the department|the front desk".split("|"), "p": "Leeds Dover Bolton Exeter York".split(),
    },
    "sv": {
        "i": "idiot svin subba parasit fitta hora slödder kräk as jävel fjant nolla tönt äckel dåre förlorare luder".split(), "g": "utlänningar|kvinnor|invandrare|muslimer|judar|gamla|bögar|sådana människor".split("|"),
        "r": "kock svetsare lärare säljare".split(), "d": "lagret butiken köket kontoret verkstaden".split(), "p": "Lund Borås Gävle".split(),
    },
    "nb": {
        "i": "idiot svin parasitt taper hore kjerring drittsekk tosk rasshøl fitte tulling slask kødd avskum".split(), "g": "utlendinger|kvinner|innvandrere|muslimer|jøder|gamle|homoer|slike folk".split("|"),
        "r": "kokk sveiser lærer selger".split(), "d": "lageret butikken kjøkkenet kontoret verkstedet".split(), "p": "Bergen Hamar Molde".split(),
    },
    "de": {
        "i": "Idiot Schwein Versager Schlampe Hure Parasit Arschloch Depp Trottel Wichser Missgeburt Penner Drecksau Vollpfosten Abschaum Nichtsnutz Dummkopf Schmarotzer".split(), "g": "Ausländer|Frauen|Einwanderer|Muslime|Juden|Alte|Schwule|solche Leute".split("|"),
        "r": "Koch Schweißer Lehrer Verkäufer".split(), "d": "das Lager|der Laden|die Küche|das Büro".split("|"), "p": "Kiel Bremen Husum".split(),
    },
}

UNSAFE = {
    "da": """[Du er|Han er|Hun er|De er|Chefen er|Min leder er|Ham der skrev det er|Alle dernede er] [en|et|nogle|bare] [dum|usel|fed|komplet|kæmpe|ynkelig|værdiløs|] {i}.
[Sikken|Hvilken|For en|Sikke en] [ynkelig |usel |][samling|bande|flok] {i}[| i {p}| alle sammen].
[Hold kæft|Hold din mund|Hold mund|Luk røven|Klap i|Skrid|Skrub af|Forsvind|Rend og hop], [din|dit|I] [dumme |ækle |ynkelige |]{i}[|, og kom aldrig igen|, og kryb hjem til {p}|, ingen gider høre på dig].
[Din |Dit |Jeres |][dumme|grimme|værdiløse|fede|ækle|stupide][| og grimme|, fede|, usle] {i}[|, du kan ingenting].
[Jeg|Vi] [smadrer|tæsker|flår|dræber|kvæler] dig[|, {i}| og din familie].
Jeg slår dig [ihjel|ned|til plukfisk].
[Jeg|Vi] [ved|har fundet ud af], hvor du [bor|arbejder|parkerer], [og vi kommer efter dig|så pas på|og du skal få bank|din {i}].
[Jeg skal nok finde|Vi finder|Jeg finder] [dig|ud af hvor du er], og [så er du færdig|så skal du få tæsk|du kommer til at bløde|du skal betale for det][|, {i}].
[Hæng|Skyd|Kvæl|Dræb] [dig|jer] [selv|bare].
[Gør os alle en tjeneste|Gør alle den glæde|Hjælp os alle] og [dø|tag livet af dig|hop ud foran et tog|spring ud fra en bro|spring ned fra taget].
[Dø|Gå hjem og dø|Gå bare hen og dø|Dø dø dø|Bare du ville dø][|, {i}|, og tag dine venner med].
[Jeg håber|Gid|Jeg ønsker], [at du|du] [får kræft|dør|rådner op|rådner|bliver kørt over|mister alt][|, og ingen vil savne dig|, ingen vil græde].
{g} er [dyr|utøj|skadedyr|rotter|parasitter|snavs|beskidte|beskidte tyve|ikke rigtige mennesker].
{g} [yngler|formerer sig|breder sig] som [rotter|kaniner|ukrudt|lopper][| og nasser på os andre| og lever af vores penge].
[De|Alle] {g} [burde|skulle|bør] [aflives|skydes|gasses|steriliseres|spærres inde|brændes|slås ihjel][| som syge dyr| som hunde].
[Ansæt aldrig|Vi vil ikke have|Luk ikke] {g}[|, de stjæler|, de er dovne og lyver|, de er beskidte].
{g} [stinker|stjæler|lyver|snylter][| og lyver| og stjæler].
[Smid|Driv|Jag|Send] [dem|{g}] [ud af landet|hjem hvor de kom fra].
Jeg hader {g}.
[Kvinder|Piger|Kællinger] [hører til|hører hjemme|skal blive] i køkkenet[|, ikke i {d}| og har intet at gøre her].
[Folk|Gamle folk|Sådan nogle] som dig [burde|skulle] [aflives|slås ihjel|aldrig være født].
[Alle|Hele holdet|Folkene] i {d} [er|må være] [hjernedøde|uden hjerne|tabt bag af en vogn|tabt på hovedet|retarderede|dumme som døre][| alle sammen].
[Send|Giv|Vis] [mig |os |][et billede af dine bryster|nøgenbilleder|nogle billeder uden tøj på|frække billeder][|, så får du jobbet|, så snakker vi om løn|, før vi taler sammen].
[Tag|Smid] [tøjet|blusen|trusserne|bukserne], [så får du jobbet|så bliver du forfremmet|skat].
Hun [knaldede|kneppede|sugede|lå] sig til [jobbet|stillingen|toppen].
Hun fik [kun jobbet|jobbet|stillingen|lønnen], fordi hun [gik i seng med chefen|sugede den|lå på knæ for dem alle|lod alle få en tur].
[Sikke|Nogle|Lækre] [patter|bryster|ben|baller], [hende ville jeg kneppe|dem ville jeg have fat i|bare synd at hun er så dum].
[Ned på|Læg dig på|Kravl på] [knæ|alle fire], [kælling|luder|so|skat].
Kom med [op på mit hotelværelse|hjem i min seng|ud i bilen], så [får du jobbet|skal jeg vise dig noget|finder vi ud af lønnen].
Han [tog|ragede|befamlede|gramsede] [hende på brysterne|på pigerne|hende i skridtet|hende på røven][| og grinede].
Han [gned|pressede] sig op ad [hende|praktikanten|kvinderne|pigerne][|, mens de andre lo].
[Sut|Slik] den[|, {i}].
Fuck [dig|jer][|, {i}].""",
    "en": """[You are|He is|She is|They are|My boss is|The manager is|Whoever runs this is|Everyone there is] [a|just a|such a|nothing but] [stupid|fat|complete|total|worthless|pathetic|] {i}.
[What a|Such a] [pathetic |sorry |]bunch of {i}s[| in {p}].
[Shut up|Shut your face|Shut your mouth|Get lost|Piss off|Go to hell|Shut the fuck up], [you|you stupid|you ugly|you filthy] {i}[|, and never come back|, and crawl home to {p}|, nobody wants to hear you].
[You |][stupid|ugly|worthless|fat|filthy|dumb][| and ugly|, fat|, useless] {i}[|, you are good for nothing].
[I|We] will [kill|strangle|beat|stab|hurt] you[|, {i}| and your family].
[I|We] [know|found out] where you [live|work|park], [and we are coming for you|so watch out|and you will get beaten|you {i}].
[I|We] will [find you|track you down], and [then you are finished|you will bleed|you will pay for this|make you suffer][|, {i}].
[Hang|Shoot|Kill|Drown] yourself.
[Do us all|Do everybody] a favour and [die|kill yourself|jump in front of a train|jump off a bridge|jump from the roof].
[Die|Just die|Go home and die|Drop dead|Why don't you die][|, {i}|, and take your friends with you].
[Die die die|Die, die|Die, {i}, die|Die die die die].
[Please |Just |]die[,|] die[,|] die[ die die|, you {i}|].
I [hope|wish] you [get cancer|die|rot|rot in hell|get run over|lose everything][|, nobody would miss you|, nobody will cry].
{g} are [animals|vermin|rats|parasites|dirt|dirty|filthy thieves|not human].
{g} [breed|multiply|spread] like [rats|rabbits|weeds|fleas][| and sponge on the rest of us| and live off our money].
[Those|All] {g} [should|ought to] be [put down|shot|gassed|sterilised|locked up|burned|killed][| like sick animals| like dogs].
[Never hire|We do not want|Do not let in] {g}[|, they steal|, they are lazy and lie|, they are dirty].
{g} [stink|steal|lie|leech][| and lie| and steal].
[Throw|Drive|Kick|Send] [them|{g}] [out of the country|back where they came from].
I hate {g}.
[Women|Girls|Bitches] belong in the kitchen[|, not in {d}| and have no place here].
[People|Old people|Folk] like you should [be put down|be killed|never have been born].
[Everybody|The whole team|The people] in {d} [is|must be|has to be] [brain dead|without a brain|dropped on the head|retarded|as thick as a brick][| to a man].
[Send|Give|Show] [me |us |][a picture of your tits|nude pictures|naked photos|pictures without clothes][|, and the job is yours|, then we discuss pay|, before we talk].
[Take off|Get out of] your [clothes|blouse|panties|trousers], [and you get the job|and I will promote you|darling].
She [slept|screwed|fucked|sucked] her way to [the job|the position|the top].
She [only got the job|got the job|got the pay], because she [slept with the boss|sucked him off|was on her knees for all of them|let everybody have a go].
[Nice|Great|What] [tits|legs|ass|boobs], [I would fuck her|I want to grab those|pity she is so dumb].
[Get down|Get|Crawl] on [your knees|all fours], [bitch|whore|slut|darling].
Come [up to my hotel room|home to my bed|out to the car], and [the job is yours|I will show you something|we will sort out your pay].
He [grabbed|groped|fondled|touched] [her breasts|the girls|her crotch|her ass][| and laughed].
He [rubbed|pressed] himself against [her|the trainee|the women|the girls][|, while the others laughed].
Suck [it|my dick][|, {i}].
Fuck [you|off][|, {i}].""",
    "sv": """[Du är|Han är|Hon är|De är|Min chef är|Den som skriver så är] [en|ett|bara] [dum|fet|komplett|värdelös|jävla|] {i}.
[Vilken|Vilket] [ynklig |]samling {i}[| i {p}].
[Håll käften|Håll mun|Stick|Försvinn|Dra åt helvete], [din|ditt] [dumma |äckliga |jävla |]{i}[|, och kryp hem till {p}].
[Din |Ditt |][dumma|fula|värdelösa|feta] {i}.
Jag [dödar|slår ihjel|krossar] dig[|, {i}].
[Jag|Vi] vet var du [bor|jobbar][| och vi kommer| och ska döda dig|, ditt {i}].
[Häng|Skjut|Döda] dig[| själv].
Gör oss alla en tjänst och [dö|ta livet av dig|hoppa framför tåget|hoppa från bron].
[Dö|Gå hem och dö|Dö dö dö][|, {i}].
Jag hoppas att du [dör|får cancer|ruttnar|förlorar allt].
{g} är [djur|ohyra|råttor|parasiter|smutsiga|smutsiga tjuvar].
{g} [förökar sig|sprider sig] som [råttor|kaniner|ogräs][| och lever på oss].
{g} borde [skjutas|avlivas|gasas|låsas in].
[Anställ aldrig|Släpp inte in] {g}[|, de stjäl|, de ljuger].
[Kasta|Kör|Skicka] ut {g} ur landet.
[Kvinnor|Tjejer] hör hemma i köket.
[Skicka|Visa] [mig |][nakenbilder|bilder utan kläder][|, så får du jobbet|, så pratar vi om lön].
[Ta av dig|Av med] kläderna[|, så får du tjänsten].
Hon [knullade|låg] sig till [jobbet|toppen].
[Ner på|Lägg dig på] knä, [subba|hora].
Kom [till mitt hotellrum|hem till min säng], så får du jobbet.
Han [tafsade på|tog|gned sig mot] [tjejerna|hennes bröst|henne][| och skrattade].
Fan ta dig[|, {i}].""",
    "nb": """[Du er|Han er|Hun er|De er|Sjefen min er|Den som skriver sånt er] [en|et|bare] [dum|feit|komplett|verdiløs|jævla|] {i}.
[For en|Hvilken] [ynkelig |]gjeng {i}[| i {p}].
[Hold kjeft|Hold munn|Stikk|Forsvinn|Dra til helvete], [din|ditt] [dumme |ekle |jævla |]{i}[|, og kryp hjem til {p}].
[Din |Ditt |][dumme|stygge|verdiløse|feite] {i}.
Jeg [dreper|slår i hjel|knuser] deg[|, {i}].
[Jeg|Vi] vet hvor du [bor|jobber][| og vi kommer| og skal drepe deg|, din {i}].
[Heng|Skyt|Drep] deg[| selv].
Gjør oss alle en tjeneste og [dø|ta livet av deg|hopp foran toget|hopp fra broen].
[Dø|Gå hjem og dø|Dø dø dø][|, {i}].
Jeg håper at du [dør|får kreft|råtner|mister alt].
{g} er [dyr|utøy|rotter|parasitter|skitne|skitne tyver].
{g} [formerer seg|sprer seg] som [rotter|kaniner|ugress][| og lever av oss].
{g} burde [skytes|avlives|gasses|låses inne].
[Ansett aldri|Ikke slipp inn] {g}[|, de stjeler|, de lyver].
[Kast|Jag|Send] {g} ut av landet.
[Kvinner|Jenter] hører hjemme på kjøkkenet.
[Send|Vis] [meg |][nakenbilder|bilder uten klær][|, så får du jobben|, så snakker vi om lønn].
[Ta av deg|Av med] klærne[|, så får du stillingen].
Hun [pulte|lå] seg til [jobben|toppen].
[Ned på|Legg deg på] knærne, [kjerring|hore].
Kom [til hotellrommet mitt|hjem i sengen min], så får du jobben.
Han [klådde på|tok|gned seg mot] [jentene|brystene hennes|henne][| og lo].
Faen ta deg[|, {i}].""",
    "de": """[Du bist|Er ist|Sie ist|Mein Chef ist|Wer so schreibt, ist] [ein|eine|nur ein] [dummer|fetter|kompletter|wertloser|elender|] {i}.
[Was für ein|So ein] [elender |]Haufen {i}[| in {p}].
[Halt die Fresse|Halt den Mund|Halt die Klappe|Hau ab|Verpiss dich|Verschwinde], du [dummer |dreckiger |]{i}[|, und kriech zurück nach {p}].
[Du |][dummer|hässlicher|wertloser|fetter] {i}.
Ich [töte|erwürge|zerquetsche] dich[|, du {i}].
Ich bringe dich um[|, du {i}].
[Ich weiß|Wir wissen], wo du [wohnst|arbeitest][|, und wir kommen|, du {i}].
[Häng dich auf|Erschieß dich|Bring dich um].
Tu uns allen einen Gefallen und [stirb|bring dich um|spring vor den Zug|spring von der Brücke].
[Stirb|Geh nach Hause und stirb|Stirb endlich][|, du {i}].
Ich hoffe, du [stirbst|bekommst Krebs|verrottest|verlierst alles].
{g} sind [Tiere|Ungeziefer|Ratten|Parasiten|dreckig|dreckige Diebe].
{g} [vermehren|verbreiten] sich wie [Ratten|Kaninchen|Unkraut][| und leben von uns].
{g} [sollte man|muss man] [erschießen|vergasen|einsperren|einschläfern].
[Stellt niemals|Lasst keine] {g} [ein|rein][|, die stehlen|, die lügen].
[Werft|Jagt|Schickt] {g} aus dem Land.
[Frauen|Mädchen|Weiber] gehören in die Küche.
[Schick|Zeig] [mir |][Nacktbilder|Bilder ohne Kleider][|, dann hast du die Stelle|, dann reden wir über Geld].
[Zieh dich aus|Runter mit den Kleidern][|, dann hast du die Stelle].
Sie hat sich [hochgeschlafen|die Stelle erfickt].
[Runter auf|Geh auf] die Knie, [Schlampe|Hure].
Komm [auf mein Hotelzimmer|in mein Bett], dann hast du die Stelle.
Er [begrapschte|befummelte] [die Mädchen|sie|ihre Brüste][| und lachte].
Fick dich[|, du {i}].""",
}

SAFE = {
    "da": """[Vi tolererer ikke|Vi accepterer aldrig|Der er forbud mod] [mobning|chikane|hadtale|trusler|sexchikane|racisme] [på arbejdspladsen|i {d}|her].
[Klager over|Sager om|Anmeldelser af] [chikane|trusler|vold|seksuelle krænkelser] behandles [fortroligt|af ledelsen|i {d}].
[Du fjerner|Moderatoren sletter|Filteret fanger] [skældsord|ord] som {i} [og|eller] {i}[| fra kommentarerne].
Vi [fjerner|skjuler|sletter] [kommentarer|indlæg] med [skældsord|ord] [såsom|som] {i} [og|eller] {i}.
[En leder|En kollega|En kunde] blev [fyret|anmeldt|bortvist], efter at han [kaldte|havde kaldt] en [elev|kollega|ansat] {i}.
[Kurset|Foredraget|Bogen] handler om [racisme|hadforbrydelser|vold|seksuelle overgreb|trusler] [mod|og] {g}.
[Klinikken|Rådgivningen] hjælper [ofre for overgreb|folk med selvmordstanker|unge om seksuel sundhed].
[Dumme spørgsmål|Dumme ideer] findes ikke[| her].
[Gården|Stalden] har [svin|søer|grise|dyr|køer], og [dyrene passes|syge dyr aflives] af en dyrlæge.
[Systemet|Programmet] [dræber|slår] processer [ihjel|ned], der hænger.
[Vi bekæmper|Firmaet bekæmper] [rotter|skadedyr|utøj|ukrudt] i {d}.
[Vi ansætter|Vi søger] gerne {g}, [alle er velkomne|og alle behandles lige].
{g} har [samme ret|lige så stor ret] til [arbejde|respekt] som andre.
Han [døde|blev dræbt] i en ulykke[|, og vi savner ham].
[Nøgne ledninger|Nøgne vægge|Fede pletter|Beskidt arbejde|Det blotte øje] er en del af [hverdagen|opgaven].
Det er en [dræberapp|bombe af en idé|sejr for taberne].
[Ned på knæ|Op på taget], når [gulvet skal lægges|tagrenden renses].""",
    "en": """[We do not tolerate|We never accept|There is a ban on] [bullying|harassment|hate speech|threats|sexual harassment|racism] [at work|in {d}|here].
[Complaints about|Cases of|Reports of] [harassment|threats|violence|sexual assault] are handled [in confidence|by management|in {d}].
[You remove|The moderator deletes|The filter catches] [insults|words] like {i} [and|or] {i}[| from the comments].
We [remove|hide|delete] [comments|posts] with [insults|words] [such as|like] {i} [and|or] {i}.
[A manager|A colleague|A customer] was [dismissed|reported|banned], after he [called|had called] a [trainee|colleague|worker] {i}.
[The course|The talk|The book] is about [racism|hate crime|violence|sexual assault|threats] [against|and] {g}.
[The clinic|The helpline] helps [victims of assault|people with suicidal thoughts|the young with sexual health].
[Stupid questions|Stupid ideas] do not exist[| here].
[The farm|The stable] has [pigs|sows|bitches|animals|cows], and [the animals are cared for|sick animals are put down] by a vet.
[The system|The program] [kills|shuts down] processes that hang.
[We control|The firm controls] [rats|vermin|pests|weeds] in {d}.
[We hire|We welcome] {g}, [everybody is welcome|and all are treated alike].
{g} have the [same|very same] right to [work|respect] as others.
He [died|was killed] in an accident[|, and we miss him].
[Naked wires|Bare walls|Fat stains|Dirty work|The naked eye] [is|are] part of [the day|the job].
It is a [killer app|bomb of an idea|win for the losers].
[Down on your knees|Up on the roof], when [the floor is laid|the gutter is cleaned].""",
    "sv": """[Vi tolererar inte|Vi godtar aldrig] [mobbning|trakasserier|hat|hot|rasism] [på jobbet|här].
[Du tar bort|Filtret fångar] [skällsord|ord] som {i}.
En chef [fick gå|blev anmäld] efter att ha kallat en elev {i}.
[Kursen|Boken] handlar om [rasism|hatbrott|våld|hot] mot {g}.
Kliniken hjälper [offer för övergrepp|unga om sexuell hälsa].
Dumma frågor finns inte.
Gården har [svin|grisar|djur].
{g} har samma rätt till arbete som andra.""",
    "nb": """[Vi tolererer ikke|Vi godtar aldri] [mobbing|trakassering|hat|trusler|rasisme] [på jobben|her].
[Du fjerner|Filteret fanger] [skjellsord|ord] som {i}.
En sjef [fikk gå|ble anmeldt] etter å ha kalt en elev {i}.
[Kurset|Boken] handler om [rasisme|hatkriminalitet|vold|trusler] mot {g}.
Klinikken hjelper [ofre for overgrep|unge om seksuell helse].
Dumme spørsmål finnes ikke.
Gården har [svin|griser|dyr].
{g} har samme rett til arbeid som andre.""",
    "de": """[Wir dulden keine|Wir akzeptieren nie] [Belästigung|Drohungen|Gewalt|Hetze] [bei der Arbeit|hier].
[Sie entfernen|Der Filter findet] [Schimpfwörter|Wörter] wie {i}.
Ein Leiter [musste gehen|wurde angezeigt], weil er einen Lehrling {i} genannt hat.
[Der Kurs|Das Buch] handelt von [Rassismus|Gewalt|Drohungen] gegen {g}.
Die Klinik hilft [Opfern von Gewalt|Jungen bei sexueller Gesundheit].
Dumme Fragen gibt es nicht.
Der Hof hält [Schweine|Tiere].
{g} haben das gleiche Recht auf Arbeit wie andere.""",
}

PLAIN = {
    "da": """[Vi søger|Firmaet søger] en {r} til {d}[| i {p}].
Som {r} får du [ansvaret for|lov til at præge] {d}.
[Lønnen|Ferien] følger [overenskomsten|aftalen].
Min [leder|chef] var [tålmodig|venlig|flink|god] og [svarede altid|hjalp mig].
[Jeg håber|Jeg ønsker], at du får [jobbet|ferie|et svar].
[Send|Giv] [ansøgningen|et billede af dit bevis], [så snakker vi om løn|så hører du fra os].
Kom [forbi|op på kontoret], så [taler vi om stillingen|viser jeg dig {d}].
[Hun|Han] fik [jobbet|stillingen], fordi hun [var dygtig|havde erfaring].
[Alle|Hele holdet|Folkene] i {d} [er glade|har erfaring|spiser sammen].
[Du er|Han er|Hun er] en [god|dygtig|rolig] {r}.
[Jeg ved|Vi ved], hvor [kontoret ligger|du kan parkere].""",
    "en": """[We are looking for|The firm needs] a {r} for {d}[| in {p}].
As a {r} you will be [responsible for|part of] {d}.
[Pay|Leave] follows the [agreement|rules].
My [manager|boss] was [patient|kind|good] and [always answered|helped me].
I [hope|wish] you get [the job|some rest|an answer].
[Send|Give] us [the application|a picture of your certificate], [then we talk about pay|and you will hear from us].
Come [by|to the office], and [we talk about the position|I will show you {d}].
[She|He] got [the job|the position], because she [was good|had experience].
[Everybody|The whole team|The people] in {d} [is glad|has experience|eats together].
[You are|He is|She is] a [good|skilled|calm] {r}.
[I know|We know], where [the office is|you can park].""",
    "sv": """Vi söker en {r} till {d}[| i {p}].
Som {r} får du ansvar för {d}.
Lönen följer avtalet.
[Du är|Han är|Hon är] en [bra|duktig] {r}.
Jag hoppas att du får [jobbet|ett svar].
Skicka [ansökan|ett brev], så pratar vi om lön.""",
    "nb": """Vi ser etter en {r} til {d}[| i {p}].
Som {r} får du ansvar for {d}.
Lønnen følger avtalen.
[Du er|Han er|Hun er] en [god|flink] {r}.
Jeg håper at du får [jobben|et svar].
Send [søknaden|et brev], så snakker vi om lønn.""",
    "de": """Wir suchen einen {r} für {d}[| in {p}].
Als {r} sind Sie für {d} zuständig.
Die Bezahlung folgt dem Tarif.
[Du bist|Er ist|Sie ist] ein [guter|ruhiger] {r}.
Ich hoffe, du bekommst [die Stelle|eine Antwort].
Schick [die Bewerbung|einen Brief], dann reden wir über die Stelle.""",
}

_CHOICE, _SLOT = re.compile(r"\[([^\[\]]*)\]"), re.compile(r"\{(\w)\}")


def phrases(kind: dict[str, str], lang: str) -> list[str]:
    return [p.strip() for p in kind[lang].split("\n") if p.strip()]


def filled(pattern: str, lang: str, rng: random.Random) -> str:
    """One sentence of a pattern."""
    s = _CHOICE.sub(lambda m: rng.choice(m.group(1).split("|")), pattern)
    s = " ".join(_SLOT.sub(lambda m: rng.choice(SLOTS[lang][m.group(1)]), s).split()).replace(" .", ".").replace(" ,", ",")
    return s[:1].upper() + s[1:]
